"""Training-data operators: chat formatting, near-duplicates, quality rules,
packing, secret scans, token counts, language identification, language-model
scoring, sharding and benchmark decontamination.

Every operator takes DataFrames and returns DataFrames.  Nothing else in the
library imports this subpackage; ``queries`` holds the registered queries."""
