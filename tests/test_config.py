import pytest

from docindex import IndexConfig


def test_defaults():
    cfg = IndexConfig("t")
    assert (cfg.chunk_size, cfg.chunk_overlap) == (1000, 100)
    assert (cfg.model, cfg.version) == ("mxbai-embed-large", "1.3.0")
    assert cfg.host == "http://localhost:11434"
    assert cfg.glob == "*.pdf"
    assert cfg.dimension is None and cfg.max_delete_fraction is None


@pytest.mark.parametrize("size, overlap", [(100, 100), (100, 101), (100, -1), (0, 0)])
def test_a_window_that_does_not_move_is_refused(size, overlap):
    with pytest.raises(ValueError):
        IndexConfig("t", chunk_size=size, chunk_overlap=overlap)


@pytest.mark.parametrize(
    "bad", [{"reuse": "never"}, {"max_delete_fraction": 1.5}, {"embed_batch": 0}]
)
def test_other_bad_settings(bad):
    with pytest.raises(ValueError):
        IndexConfig("t", **bad)
