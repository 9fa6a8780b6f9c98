"""One query per operator, each with an equivalent SQL statement where one exists."""

from vecflow.queries import (  # noqa: F401
    function_queries,
    operator_queries,
    plan_queries,
    source_queries,
)
from vecflow.queries.registry import ORACLES, QUERIES  # noqa: F401
