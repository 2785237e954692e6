"""Readers for city lists, forecast documents, stored API payloads and the driver tables."""
