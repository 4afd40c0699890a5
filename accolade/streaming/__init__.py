"""Keeping the entity-days current as new rows land, without a full rebuild."""
