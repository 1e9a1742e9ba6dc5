"""Whole jobs: article preparation, marts, n-gram outputs, text model."""
