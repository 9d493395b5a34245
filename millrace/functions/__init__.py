"""Column expressions shared by the operators; every one is native, none is a Python UDF."""
