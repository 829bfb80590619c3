"""Column expressions: no function here touches a DataFrame or runs a job."""
