"""Stages as functions from DataFrame to DataFrame."""
