"""Deliveries of a stream are packed."""

import glob
import os

from claimlake import registry
from claimlake.session import checkpoint_dir
from conftest import SF_SMALL


def test_stream_deliveries_are_packed(spark):
    registry.queries()["stream_silver_claims"](spark, SF_SMALL)
    files = glob.glob(os.path.join(checkpoint_dir(spark).removeprefix("file:"), "stream-*", "incoming", "*", "part-*"))
    assert files and all(f.endswith(".json.gz") for f in files)
