"""Readers, writers and the mapping of generic tables to engine inputs."""
