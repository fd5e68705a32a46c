"""Landed pages, list files, high-water marks and shared scratch space."""
