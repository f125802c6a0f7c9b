"""The training table's occurrences are cleaned once, however often the geocoding reads them."""

import pytest


def test_cleaned_occurrences_are_written_once_and_hold_the_rows(spark, sf_small, monkeypatch):
    from habiflow.operators import clean as C
    from habiflow.plans import fixtures as FX
    from habiflow.plans import training as T
    a, b = T.cleaned(spark, sf_small), C.clean_occurrences(FX.occ(spark, sf_small))
    assert a.columns == b.columns and a.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    monkeypatch.setattr(C, "clean_occurrences", lambda *x: pytest.fail("cleaned again"))
    assert T.presences(spark, sf_small).count() > 0
