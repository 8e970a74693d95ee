import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gazetick.session import build_session

    return build_session(
        "tests", cores="8", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")), spark__sql__shuffle__partitions="4"
    )
