import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from chainlens.session import get_spark

    return get_spark("local[4]", 4, conf={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
