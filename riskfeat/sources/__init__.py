"""Inputs and outputs: raw CSV readers, fixture views over the test tables, sinks."""

from .fixtures import base_table, label_and_bases, op_log, trans_log  # noqa: F401
from .readers import combine, load_raw, write_table  # noqa: F401
