"""Fixtures for the operators of the llm subpackage; the session comes from above."""
