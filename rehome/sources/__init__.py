"""Snapshot readers (SRC1-SRC5) and writers (SNK1-SNK5)."""
