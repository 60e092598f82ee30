"""Shift-log quality and KPI engine expressed as Spark DataFrame plans."""
