"""PySpark library for company-intake data: plain DataFrame functions, one module per concern."""
