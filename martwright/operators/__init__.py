"""Reusable distributed operators shared by the plans."""
