"""Model search, ensembling and scoring as Spark ML jobs."""
