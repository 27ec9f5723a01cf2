"""Whole stages composed from operators."""
