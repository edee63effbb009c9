"""segmint: audience preparation and activation as Spark jobs.

Normalise and SHA-256 identifier columns, reshape to one row per hashed
identifier, split under a destination's size cap, write partitioned
output, and route new output files to their audiences with a Structured
Streaming job.
"""

from .spec import AudienceSpec, PiiField

__all__ = ["AudienceSpec", "PiiField"]
