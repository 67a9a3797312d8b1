"""Curate call transcripts and score fraud labels as Spark jobs."""
