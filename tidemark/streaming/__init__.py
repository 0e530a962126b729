"""Keeping the tables current as files arrive."""
