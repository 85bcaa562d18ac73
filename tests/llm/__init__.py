"""Tests of vulnsift.llm."""
