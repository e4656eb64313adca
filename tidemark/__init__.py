"""Change-data analytics as Spark jobs: parse, land, model, reconcile, alert."""
