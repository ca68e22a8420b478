"""Keyed result tables that are safe to replay."""
