"""Named queries over the driver's tables and the end-to-end jobs built on them."""

from tidewater.plans import (  # noqa: F401
    change_queries,
    dashboard,
    delivery_queries,
    io_queries,
    jobs,
    join_queries,
    keyed_queries,
    stream_queries,
    text_queries,
    window_queries,
)
from tidewater.plans.registry import ORACLES, QUERIES, table  # noqa: F401
