"""Warehouse operators and business marts as pure DataFrame-to-DataFrame functions."""
