"""Plans: the query catalog over driver tables, its oracle SQL, and the timed job."""

from tokentally.plans.catalog import QUERIES
from tokentally.plans.oracle import ORACLE_SQL
from tokentally.plans.timing import timed_word_count

__all__ = ["ORACLE_SQL", "QUERIES", "timed_word_count"]
