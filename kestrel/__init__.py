"""Customer-profile tagging and segmentation operators on Spark DataFrames.

The main entry points, by task:

* read business data from a tag rule: :func:`parse_rule`, :func:`read_source`,
  :func:`wide_scan`;
* label users: :func:`rule_match`, :func:`range_match`, :func:`most_frequent`;
* measure and score: :func:`rfm_measures`, :func:`rfe_measures`,
  :func:`psm_measures`, :func:`score`;
* tag models and the template: :mod:`kestrel.plans.models`,
  :func:`run_tag_model`, :mod:`kestrel.plans.jobs`;
* keep the profile: :func:`upsert`, :class:`ProfileStore`,
  :class:`BucketedProfileTable`, :func:`to_cells`.
"""

from kestrel.functions.scoring import score
from kestrel.operators.bucket_store import BucketStore
from kestrel.operators.match import range_match, rule_match
from kestrel.operators.measures import most_frequent, psm_measures, rfe_measures, rfm_measures
from kestrel.operators.profile import BucketedProfileTable, ProfileStore, to_cells, upsert
from kestrel.plans.models import run_tag_model
from kestrel.sources.meta import parse_rule, read_source, wide_scan

__version__ = "0.1.0"

__all__ = ["score", "range_match", "rule_match", "most_frequent", "psm_measures", "rfe_measures",
           "rfm_measures", "BucketStore", "BucketedProfileTable", "ProfileStore", "to_cells", "upsert",
           "run_tag_model", "parse_rule", "read_source", "wide_scan"]
