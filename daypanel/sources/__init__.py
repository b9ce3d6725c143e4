"""Schemas, readers, writers, staged tables and the stand-in inputs."""
