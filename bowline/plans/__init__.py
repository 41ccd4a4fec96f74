"""End-to-end jobs: preprocessing and classification."""
