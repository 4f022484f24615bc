"""Operators of a training-data pipeline (chat formatting, de-duplication, packing and so on)."""
