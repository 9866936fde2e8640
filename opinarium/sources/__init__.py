"""Readers. Every reader takes or fixes its schema; none infers one."""
