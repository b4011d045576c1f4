"""Operators composed into the sales pipelines and the registered queries."""
