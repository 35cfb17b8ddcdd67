"""Reusable DataFrame operators the analyses are built from."""

import sys

from pyspark import cloudpickle

from storefront.operators.aggregates import share_pct, success_rate, tiered_value, totals_by  # noqa: F401
from storefront.operators.asof import as_of, carry_forward  # noqa: F401
from storefront.operators.cumulative import period_totals, running_totals  # noqa: F401
from storefront.operators.exclusion import exclude_keys, missing_in_range, missing_in_range_by  # noqa: F401
from storefront.operators.fixpoint import fixpoint, reachable  # noqa: F401
from storefront.operators.heavy import top_heavy  # noqa: F401
from storefront.operators.lists import compose_list, explode_ids, substrings  # noqa: F401
from storefront.operators.membership import with_membership, with_periods  # noqa: F401
from storefront.operators.numbering import append_numbered, compose_pieces, number_rows  # noqa: F401
from storefront.operators.patterns import like_join  # noqa: F401
from storefront.operators.periods import before_after, period_sums  # noqa: F401
from storefront.operators.quality import append_rows, insert_values, validate_rows  # noqa: F401
from storefront.operators.ranking import rows_at_extreme, top_by_count, top_overall  # noqa: F401
from storefront.operators.rollup import count_sets, distinct_by_levels, distinct_sets, merge_sets  # noqa: F401

# Helpers that run inside tasks travel with the job: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
