"""Streaming entry points. The original has no stream processing; its daily
batch refresh is re-expressed as a file-triggered Structured Streaming job
(see ``refresh``)."""
