"""Fingerprints of texts in which one word pair is very frequent."""

from monthgrain.llm import fingerprint


def test_frequent_pair_does_not_wrap():
    own, edited = (fingerprint.fingerprint("x " * n) for n in (40_000, 30_000))
    assert 0.7 < fingerprint.likeness(own, edited) < 0.95
