"""Distributed models over cleaned incidents (MLlib)."""
