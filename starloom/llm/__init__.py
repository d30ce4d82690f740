"""Operators on document texts: token counts, packing, mixing and content scores."""
