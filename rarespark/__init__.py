"""Rare-event binary classification analytics, expressed as Spark jobs."""
