"""Incremental form of the daily job (Structured Streaming).

The reference is a nightly batch; nothing in it streams.  The one part
that is naturally incremental is the visit-fact step (Q06 + Q08): each new
visit row becomes one fact row that never changes.  ``visit_facts_stream``
runs that step over a landing folder of visit files with an
``availableNow`` trigger, so a scheduled run processes only the files that
arrived since the last run and the checkpoint makes the output
exactly-once.  The unified table (ranks, due-list matching) stays a batch
job over the accumulated facts.
"""

from visitwise.streaming.visits import start_visit_facts, visit_facts_stream  # noqa: F401
