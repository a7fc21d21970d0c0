"""Scholarly-works analytics and corpus preparation on Spark."""
