"""Readers and derived inputs."""
