"""Readers, stand-in views, word lists, file round trips and spines."""
