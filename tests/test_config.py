import pytest

from sheafline.config import Profile, load_profile


def test_profiles(tmp_path):
    p = tmp_path / "p.yaml"
    assert load_profile(p) == Profile()
    p.write_text("")
    assert load_profile(p) == Profile()
    p.write_text("chunk_size: '700'\npersonal_marks: личное\ngood_score: 1\nodd: 3\n", encoding="utf-8")
    with pytest.warns(UserWarning, match="odd"):
        got = load_profile(p)
    assert (got.chunk_size, got.personal_marks, got.good_score) == (700, ("личное",), 1.0)
    for bad in ("chunk_size: 1.5", "chunk_size:", "- a"):
        p.write_text(bad)
        with pytest.raises(ValueError):
            load_profile(p)
