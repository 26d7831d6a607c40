"""Part of cliploom."""
