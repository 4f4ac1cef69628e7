"""Set-based clinical-trial risk analytics on PySpark."""
