"""Whole plans: normalizing, overlaying, delivering, and the layer interface."""
