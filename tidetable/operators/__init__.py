"""Relational, window, statistical and forecasting operators over panels."""
