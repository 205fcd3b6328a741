"""Queries over the test tables, and the same in SQL."""

from . import citing, filing, interviewing, layouts, queueing, relations, sequences, texts

MODULES = (sequences, relations, texts, layouts, citing, queueing, interviewing, filing)
