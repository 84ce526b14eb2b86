"""shelfwise: weekly retail product reporting on Spark.

Sources read the product feed, the popularity ranking, ad reports and
web-analytics reports as DataFrames; ``plans`` compose them into the
report tables (products sold / not sold, decline, margins, sizes and the
monthly / weekly roll-ups).  Everything is built from DataFrame and SQL
expressions so Catalyst can prune, push down and pick join strategies.
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming", "session"]
