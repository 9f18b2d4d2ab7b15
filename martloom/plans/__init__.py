"""Modelled tables, measures, pipelines and the registered queries."""
