"""The model graph (staging -> intermediate -> marts) and its build."""

from rankforge.plans.graph import MODEL_ORDER, ModelGraph, build  # noqa: F401
