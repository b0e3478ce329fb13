"""Every registered query by name, with the SQL that gives the same rows."""

from . import checks, clips, records, texts, timeline, tracks

FLAGSHIP = "merge_short"
QUERIES: dict = timeline.QUERIES | records.QUERIES | texts.QUERIES | tracks.QUERIES | clips.QUERIES | checks.QUERIES
SQL: dict = timeline.SQL | records.SQL | texts.SQL | tracks.SQL | clips.SQL | checks.SQL
