"""Loading and auditing property-appraisal reports as ordinary Spark jobs."""
