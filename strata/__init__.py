"""strata: a Spark-native layered analytics engine for entity-and-review data.

raw NDJSON -> typed landing -> normalised core tables -> marts -> NDJSON publish,
all as DataFrame plans that Catalyst and adaptive execution optimise.

    from strata import build_session
    from strata.plans import landing, core, marts, flows
"""

from strata.session import build_session, ensure_checkpoint_dir, scratch_path

__version__ = "0.1.0"

__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path", "__version__"]
