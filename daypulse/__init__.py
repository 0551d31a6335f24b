"""daypulse: product analytics (sessions, active users, retention, funnels,
revenue, refunds, signups, geo lookup, log ingestion) as Spark DataFrame and
Structured Streaming operators.

Every operator is a plain function ``DataFrame(s) + parameters -> DataFrame``:
no action inside, no ``collect``, no RDDs. Catalyst plans the work; the
functions only declare it.
"""

__version__ = "0.1.0"
