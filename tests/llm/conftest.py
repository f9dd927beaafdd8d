import pytest

from tests.conftest import SF_CHECK, SF_SMALL


@pytest.fixture
def sf_small():
    return SF_SMALL


@pytest.fixture
def sf_check():
    return SF_CHECK
