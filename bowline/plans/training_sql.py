"""SQL that repeats the training of small networks step by step, to check the distributed trainer against.

One table per step holds all parameters, (learner, layer, i, j, w, v): weight and velocity from input i (-1: the bias)
to output j. Separable starting weights keep hidden units whose numbers differ by 16 equal, so of a wide layer SQL
computes 16 units and counts each as often as it occurs (``n_unit``); every full unit takes the same steps.
"""

from __future__ import annotations

from dataclasses import dataclass

from bowline.operators.trainer import Network

UNITS = 16  # fixed value: the period of ``separable_weights``


@dataclass(frozen=True)
class Plan:
    """``hidden``: SQL for the width of a first hidden layer, None without. ``batches``: None for full batches."""

    epochs: int
    hidden: str | None = None
    workers: int = 1
    batches: int | None = None
    average_every: int | None = None


def training_ctes(plan: Plan) -> tuple[str, str, str]:
    """(CTEs, the last parameters' CTE, SELECT of the losses (epoch, loss)).

    They read ``entries(doc_id, feature, value)``, ``docs(doc_id, split, label)`` and ``width(n_features)``.
    """
    c = Network((1, 1))
    depth = 3 if plan.hidden else 2
    step = lambda n, factor, first: f"((({n}) * {factor} + {first}) % 16 + 0.5) / 8.0 - 1.0"
    ctes = [
        "known_classes AS MATERIALIZED (SELECT label, row_number() OVER (ORDER BY label) - 1 AS j FROM"
        " (SELECT DISTINCT label FROM docs WHERE split = 'training'))",
        f"""layers AS MATERIALIZED (
  SELECT k, f.n_features, {f"CAST({plan.hidden} AS BIGINT)" if plan.hidden else "k"} AS h
  FROM (SELECT count(*) AS k FROM known_classes), (SELECT CAST(n_features AS BIGINT) AS n_features FROM width) f)""",
        # How many full units stand behind a unit of layer 1.
        f"""units AS MATERIALIZED (
  SELECT u.range AS unit, (SELECT (h - 1 - u.range) // {UNITS} + 1 FROM layers) AS n_unit
  FROM range({UNITS}) u WHERE u.range < (SELECT h FROM layers))""",
    ]
    digits = "md5(CAST(doc_id AS VARCHAR))"
    number = lambda first: f"CAST('0x' || substr({digits}, {first}, 7) AS BIGINT)"
    ctes.append(f"""learning AS MATERIALIZED (
  SELECT doc_id, c.j AS class_id, {f"{number(1)} % {plan.workers}" if plan.batches else "0"} AS learner,
         {f"{number(8)} % {plan.batches}" if plan.batches else "0"} AS batch
  FROM docs JOIN known_classes c USING (label) WHERE split = 'training')""")

    # (layer, SQL of its inputs, of its outputs, of their numbers): widths in full units.
    widths = [("n_features", "h"), *[("h", "k")] * (depth > 1), *[("k", "k")] * (depth > 2)]
    parts = []
    for layer, (n, m) in enumerate(widths, 1):
        inputs = f"range((SELECT {n} FROM layers))" if layer != 2 else "(SELECT unit AS range FROM units)"
        outputs = f"range((SELECT {m} FROM layers))" if layer != 1 else "(SELECT unit AS range FROM units)"
        scale = f"3.0 * sqrt(2.0 / (SELECT {n} + {m} FROM layers))"
        parts.append(f"SELECT {layer} AS layer, i.range AS i, j.range AS j, {scale} * ({step('i.range', 7, 3)}) * ({step('j.range', 5, 1)}) AS w FROM {inputs} i, {outputs} j")
        parts.append(f"SELECT {layer}, -1, j.range, 0.0 FROM {outputs} j")
    union = "\n  UNION ALL ".join(parts)
    ctes.append(f"p0 AS MATERIALIZED (SELECT layer, i, j, CAST(w AS DOUBLE) AS w, CAST(0.0 AS DOUBLE) AS v FROM ({union}))")

    now, losses, at = "p0", [], 0
    for epoch in range(1, plan.epochs + 1):
        batches = list(range(plan.batches)) if plan.batches else [None]
        every = plan.average_every or len(batches)
        for first in range(0, len(batches), every):
            group = batches[first : first + every]
            at += 1
            ctes.append(f"s{at} AS MATERIALIZED (SELECT l.learner, p.* FROM {now} p, (SELECT DISTINCT learner FROM learning) l)")
            state = f"s{at}"
            for batch in group:
                at += 1
                where = "" if batch is None else f" WHERE batch = {batch}"
                ctes += step_ctes(at, state, where, depth, c)
                losses.append((epoch, f"loss{at}", batch is None))
                state = f"s{at}"
            at += 1
            used = "" if group == [None] else f" WHERE batch IN ({', '.join(map(str, group))})"
            ctes.append(f"""p{at} AS MATERIALIZED (
  SELECT layer, i, j, sum(w * n) / sum(n) AS w, sum(v * n) / sum(n) AS v
  FROM {state} JOIN (SELECT learner, count(*) AS n FROM learning{used} GROUP BY learner) USING (learner) GROUP BY layer, i, j)""")
            now = f"p{at}"
    rows = " UNION ALL ".join(f"SELECT {e} AS epoch, loss, n, penalty FROM {name}" for e, name, _ in losses)
    # Full batches report the penalty too; learners report the loss of their documents alone.
    penalty = " + max(penalty)" if not plan.batches else ""
    losses_sql = f"SELECT CAST(epoch AS INTEGER) AS epoch, sum(loss) / sum(n){penalty} AS loss FROM ({rows}) GROUP BY epoch"
    return ",\n".join(ctes), now, losses_sql


def forward_ctes(name: str, params: str, docs: str, depth: int, by_learner: bool) -> list[str]:
    """z<layer>_<name>(doc_id, j, z) for every layer; ``docs`` is a table with doc_id (and learner)."""
    leak, out = Network((1, 1)).leak, []
    same = " AND p.learner = d.learner" if by_learner else ""
    for layer in range(1, depth + 1):
        if layer == 1:
            inner = f"SELECT d.doc_id, p.j, e.value * p.w AS z FROM {docs} d JOIN entries e USING (doc_id) JOIN {params} p ON p.layer = 1 AND p.i = e.feature{same}"
        else:
            below = f"z{layer - 1}_{name}"
            times = " * u.n_unit" if layer == 2 else ""
            units = " JOIN units u ON u.unit = a.j" if layer == 2 else ""
            inner = f"SELECT d.doc_id, p.j, a.a * p.w{times} AS z FROM {docs} d JOIN {below} a USING (doc_id){units} JOIN {params} p ON p.layer = {layer} AND p.i = a.j{same}"
        bias = f"SELECT d.doc_id, p.j, p.w FROM {docs} d JOIN {params} p ON p.layer = {layer} AND p.i = -1{same}"
        active = "z" if layer == depth else f"CASE WHEN z > 0 THEN z ELSE {leak} * z END"
        out.append(f"z{layer}_{name} AS MATERIALIZED (SELECT doc_id, j, z, {active} AS a FROM (SELECT doc_id, j, sum(z) AS z FROM ({inner} UNION ALL {bias}) GROUP BY doc_id, j))")
    return out


def step_ctes(at: int, state: str, where: str, depth: int, c: Network) -> list[str]:
    """One step of every learner that has documents in the batch; the others stay as they are."""
    name = str(at)
    out = [f"b{at} AS MATERIALIZED (SELECT * FROM learning{where})"]
    out += forward_ctes(name, state, f"b{at}", depth, True)
    out.append(f"""q{at} AS MATERIALIZED (
  SELECT doc_id, j, z - top - ln(sum(exp(z - top)) OVER (PARTITION BY doc_id)) AS logp
  FROM (SELECT *, max(z) OVER (PARTITION BY doc_id) AS top FROM z{depth}_{name}))""")
    times = "CASE WHEN layer = 1 THEN (SELECT n_unit FROM units WHERE unit = j) WHEN layer = 2 THEN (SELECT n_unit FROM units WHERE unit = i) ELSE 1 END"
    out.append(f"""loss{at} AS MATERIALIZED (
  SELECT coalesce((SELECT -sum(logp) FROM q{at} JOIN b{at} b USING (doc_id) WHERE j = class_id), 0.0) AS loss, (SELECT count(*) FROM b{at}) AS n,
         (SELECT {0.5 * c.l2!r} * sum(w * w * {times}) FROM {state} WHERE i >= 0) AS penalty)""")
    out.append(f"d{depth}_{name} AS MATERIALIZED (SELECT b.learner, q.doc_id, q.j, exp(logp) - CASE WHEN j = class_id THEN 1.0 ELSE 0.0 END AS d FROM q{at} q JOIN b{at} b USING (doc_id))")
    for layer in range(depth - 1, 0, -1):
        out.append(f"""d{layer}_{name} AS MATERIALIZED (
  SELECT d.learner, d.doc_id, p.i AS j, sum(d.d * p.w) * any_value(CASE WHEN a.a > 0 THEN 1.0 ELSE {c.leak} END) AS d
  FROM d{layer + 1}_{name} d JOIN {state} p ON p.layer = {layer + 1} AND p.i >= 0 AND p.j = d.j AND p.learner = d.learner
  JOIN z{layer}_{name} a ON a.doc_id = d.doc_id AND a.j = p.i GROUP BY d.learner, d.doc_id, p.i)""")
    sums = [f"SELECT d.learner, 1 AS layer, e.feature AS i, d.j, sum(e.value * d.d) AS g FROM d1_{name} d JOIN entries e USING (doc_id) GROUP BY ALL"]
    sums += [
        f"SELECT d.learner, {layer}, a.j, d.j, sum(a.a * d.d) FROM d{layer}_{name} d JOIN z{layer - 1}_{name} a USING (doc_id) GROUP BY ALL"
        for layer in range(2, depth + 1)
    ]
    sums += [f"SELECT learner, {layer}, -1, j, sum(d) FROM d{layer}_{name} GROUP BY ALL" for layer in range(1, depth + 1)]
    out.append(f"g{at} AS MATERIALIZED ({' UNION ALL '.join(sums)})")
    out.append(f"""s{at} AS MATERIALIZED (
  SELECT learner, layer, i, j, CASE WHEN n IS NULL THEN w ELSE w + {1 + c.momentum!r} * ({c.momentum!r} * v - {c.learning_rate!r} * g) - {c.momentum!r} * v END AS w,
         CASE WHEN n IS NULL THEN v ELSE {c.momentum!r} * v - {c.learning_rate!r} * g END AS v
  FROM (SELECT s.*, n, coalesce(g.g, 0.0) / n + CASE WHEN s.i >= 0 THEN {c.l2!r} * s.w ELSE 0.0 END AS g
        FROM {state} s LEFT JOIN (SELECT learner, count(*) AS n FROM b{at} GROUP BY learner) USING (learner)
        LEFT JOIN g{at} g ON g.learner = s.learner AND g.layer = s.layer AND g.i = s.i AND g.j = s.j))""")
    return out


def predictions_ctes(params: str, depth: int) -> str:
    """``predicted(split, doc_id, label, prediction)`` of both sets by the parameters of ``params``."""
    ctes = forward_ctes("last", params, "docs", depth, False)
    ctes.append(f"""predicted AS MATERIALIZED (
  SELECT split, doc_id, d.label, c.label AS prediction FROM docs d
  JOIN (SELECT doc_id, j, row_number() OVER (PARTITION BY doc_id ORDER BY z DESC, j) AS place FROM z{depth}_last) z USING (doc_id)
  JOIN known_classes c USING (j) WHERE place = 1)""")
    return ",\n".join(ctes)
