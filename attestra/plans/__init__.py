"""End-to-end jobs: landing, normalisation, review, evaluation.  Steps meet in written tables."""
