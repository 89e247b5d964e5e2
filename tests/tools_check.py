"""Test-side bridge to tools/check_oracle.py."""
import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

from check_oracle import compare  # noqa: E402


def compare_one(spark, sf_dir, name):
    return compare(spark, sf_dir, [name])[name]
