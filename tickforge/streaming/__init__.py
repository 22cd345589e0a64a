"""Continuous landing of messages."""
