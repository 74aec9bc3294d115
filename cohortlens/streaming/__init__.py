"""Streaming entry points. The reference has no streaming; the row-local
operators (request parsing / normalisation, floors, keyword flags, encoder
transforms) use no UDF and no global aggregate at transform time, so they
apply unchanged to a streaming DataFrame."""
