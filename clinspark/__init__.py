"""Clinical-trial tabulation tables to a typed patient data model, as Spark DataFrame jobs."""
