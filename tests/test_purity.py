"""No clock, no chance and no order of arrival in the engine."""

from tools.purity import findings


def test_nothing_makes_two_runs_differ():
    assert list(findings()) == []


def test_the_check_sees_what_it_looks_for(tmp_path):
    (tmp_path / "a.py").write_text("F.rand(1)\nrng = np.random.default_rng()\nok = np.random.default_rng([1])\nt = time.time()\n")
    assert [(line, name) for _, line, name in findings(tmp_path)] == [(1, "rand"), (2, "default_rng"), (4, "time")]
