"""Schemas, readers, sinks, and the projection of the supplied tables into the league schema."""
