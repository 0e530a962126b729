"""Operators put together: the Bronze-Silver-Gold job, its answers and reports."""
