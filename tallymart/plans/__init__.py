"""Marts, metrics and business queries composed from the operators."""
