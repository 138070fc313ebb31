"""Structured Streaming: the medallion layers as streaming queries."""

from meterlake.streaming.layers import (
    LayerPaths,
    read_layer_stream,
    run_bounded,
    start_medallion,
    write_stream,
)

__all__ = ["LayerPaths", "read_layer_stream", "run_bounded", "start_medallion", "write_stream"]
