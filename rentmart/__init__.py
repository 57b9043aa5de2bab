"""rentmart: a PySpark warehouse for short-stay rental listings.

Layers: ``sources`` (CSV feeds, table sinks, the test-table mapping),
``functions`` (column expressions and conditional aggregates), ``operators``
(surrogate keys, joins, period-over-period windows, data-quality checks),
``plans`` (dimensions, fact, marts, ad-hoc questions, the full rebuild) and
``streaming`` (incremental refresh of the touched months).

The most used entry points are importable from the package itself::

    from rentmart import build_session, run_pipeline, IncrementalMarts, marts
"""

from __future__ import annotations

import importlib

__version__ = "0.1.0"

_EXPORTS = {
    "build_session": ("rentmart.session", "build_session"),
    "run_pipeline": ("rentmart.plans.pipeline", "run_pipeline"),
    "build_marts": ("rentmart.plans.pipeline", "build_marts"),
    "IncrementalMarts": ("rentmart.streaming.incremental", "IncrementalMarts"),
    "read_feed": ("rentmart.sources.csv_feed", "read_feed"),
    "dense_surrogate_key": ("rentmart.operators.keys", "dense_surrogate_key"),
    "marts": ("rentmart.plans.marts", None),
    "adhoc": ("rentmart.plans.adhoc", None),
    "dims": ("rentmart.plans.dims", None),
    "fact": ("rentmart.plans.fact", None),
    "quality": ("rentmart.operators.quality", None),
}

__all__ = sorted(_EXPORTS)


def __getattr__(name: str):
    # imported on first use, so `import rentmart` stays light
    if name not in _EXPORTS:
        raise AttributeError(f"module 'rentmart' has no attribute {name!r}")
    module, attr = _EXPORTS[name]
    mod = importlib.import_module(module)
    return mod if attr is None else getattr(mod, attr)
