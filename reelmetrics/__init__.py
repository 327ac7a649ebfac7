"""reelmetrics: video, channel and comment analytics as Spark DataFrame jobs.

Every public function takes DataFrames or Columns and returns them; nothing here
creates a session. Plans are declarative, so Catalyst and AQE choose the physical
strategy, and the few places that need care at scale (hot keys, exact medians,
vector neighbours) live in ``operators``.
"""
