"""All registered queries."""

from codesieve.plans import (  # noqa: F401
    model_queries,
    rule_queries,
    set_queries,
    source_queries,
    syntax_queries,
    text_queries,
    vector_queries,
)
from codesieve.plans.registry import ORACLES, QUERIES  # noqa: F401
