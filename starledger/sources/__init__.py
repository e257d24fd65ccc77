"""Landed JSON pages, catalog CSV files, landing status and the snapshot store."""
