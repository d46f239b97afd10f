"""Pipelines, adapters and registered queries."""
