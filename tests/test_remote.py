import pytest

from gleaner.operators import remote


class Fake:
    def __init__(self, polls=2, flaky=1):
        self.polls, self.flaky, self.calls = polls, flaky, []

    def submit(self, calls):
        self.calls.append(calls)
        return "b1"

    def ended(self, batch):
        if self.flaky:
            self.flaky -= 1
            raise ConnectionError
        self.polls -= 1
        return self.polls < 0

    def results(self, batch):
        own = sorted(self.calls[0])
        return [(own[0][0], "yes", 0.5, None), ("stranger", "no", 1.0, None), *[(k, None, None, "refused") for k, _ in own[2:]]]


def _calls(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    return remote.prepare(rows, "m", "p" * 8, 10, 100, 1.0, 1.0)


def test_a_batch_is_submitted_waited_for_and_collected(spark):
    calls = _calls(spark, ["abcd", "efgh", "abcd", None, ""])
    assert calls.count() == 3 and sorted(round(r["usd"] * 1e6, 6) for r in calls.collect()) == [102.0, 103.0, 103.0]
    slept, named, fake = [], [], Fake()
    got = {r["call_key"]: tuple(r)[1:] for r in remote.answered(calls, fake, 1.0, on_submit=named.append, poll=5, sleep=slept.append).collect()}
    keys = sorted(got)
    assert [got[k] for k in keys] == [("yes", 0.5, None), (None, None, "no answer"), (None, None, "refused")]
    assert slept == [1.0, 5, 5] and named == ["b1"] and len(fake.calls) == 1


def test_batches_keep_to_the_room_and_can_be_taken_up(spark):
    calls = _calls(spark, ["a", "b", "c", "d"])
    assert remote.fitting(calls, 206e-6).count() == 2 and remote.fitting(calls, 206e-6, 0.5).count() == 4 and remote.fitting(calls, 1, most=3).count() == 3
    assert remote.answered(calls, Fake(), 0.0).count() == 0
    now = iter(range(0, 1000, 50))
    with pytest.raises(remote.Pending) as late:
        remote.answered(calls, Fake(99, 0), 1.0, longest=100, clock=lambda: next(now), sleep=lambda s: None)
    again = Fake(0, 0)
    again.calls = [[(r["call_key"], r["text"]) for r in calls.collect()]]
    assert remote.answered(calls, again, 1.0, batch=late.value.batch, sleep=lambda s: None).count() == 4 and len(again.calls) == 1


def test_refusals_and_long_texts_fail(spark):
    class Refusing(Fake):
        def ended(self, batch):
            error = RuntimeError("key")
            error.status_code = 401
            raise error

    with pytest.raises(RuntimeError, match="key"):
        remote.answered(_calls(spark, ["a"]), Refusing(), 1.0, sleep=lambda s: None)
    with pytest.raises(Exception, match="more than 10 characters"):
        _calls(spark, ["a" * 11]).collect()
    server = Exception()
    server.status_code = 503
    assert remote.retryable(server) and remote.retryable(TimeoutError()) and not remote.retryable(ValueError())
