import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from feedkiln import session
    s = session.get_session(master="local[4]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="feedkiln-test-ckpt-"))
    yield s


@pytest.fixture
def landing_dir(tmp_path):
    def write(files: dict[str, str]) -> str:
        for rel, content in files.items():
            p = tmp_path / rel
            p.parent.mkdir(parents=True, exist_ok=True)
            p.write_text(content, encoding="utf-8")
        return str(tmp_path)
    return write
