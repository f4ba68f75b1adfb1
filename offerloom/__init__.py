"""offerloom: job-offer analytics expressed as Spark DataFrame transformations."""
