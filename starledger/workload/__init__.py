"""Queries over the shared test tables, with equivalent SQL for checking results."""
