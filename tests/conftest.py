import zipfile
from pathlib import Path

import pytest

from cratework.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "cratework-tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.default.parallelism": "4"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_zip(tmp_path):
    def make(key: str, members: dict[str, bytes], root: Path | None = None) -> Path:
        path = (root or tmp_path / "landing") / key
        path.parent.mkdir(parents=True, exist_ok=True)
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for name, data in members.items():
                archive.writestr(name, data)
        return path

    return make
