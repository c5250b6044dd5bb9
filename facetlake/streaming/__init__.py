"""Streams of samples into tile summaries."""
