import inspect

from riskfeat.llm import hmm


def test_five_rounds_unless_told_otherwise():
    """Rounds as before they were cut for speed, in learning and in scoring."""
    assert all(inspect.signature(f).parameters["iterations"].default == 5 for f in (hmm.score, hmm.baum_welch))
