"""Scoring of tree ensembles on Spark DataFrames."""

from importlib import import_module

# Names are looked up on first use: Python workers import only the module they need.
_HOME = {
    "EnsembleModel": "operators.transformer",
    "InputError": "errors",
    "ModelError": "errors",
    "ModelTables": "sources.tables",
    "model_widths": "operators.widths",
    "parity_report": "operators.parity",
    "score_registry": "operators.registry",
    "publish_models": "sources.publish",
    "published_models": "sources.publish",
    "published_versions": "sources.publish",
    "score_registry_stream": "streaming.score",
    "score_stream": "streaming.score",
    "ship": "sources.shipping",
    "violations": "operators.validate",
    **dict.fromkeys(
        ("Input", "Leaf", "Split", "category", "constant", "forest_registry", "merge_rows", "model_rows",
         "preorder", "scalar", "stump", "stump_registry", "vector", "write_models"), "sources.build"),
}

__all__ = sorted(_HOME)


def __getattr__(name):
    if name not in _HOME:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(f"{__name__}.{_HOME[name]}"), name)
