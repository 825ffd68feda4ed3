import json
import os

import pytest

from vectorferry.operators.send import send_chunk, send_records


def test_retries_wait_after_failed_retries():
    answers, waits = [False, False, False, True], []
    assert send_chunk(lambda c: answers.pop(0), ["x"], sleep=waits.append) == 3
    assert waits == [1, 2]


def test_gives_up_after_three_retries():
    calls, waits = [], []

    def never(chunk):
        calls.append(chunk)
        raise OSError("gone")

    with pytest.raises(RuntimeError, match="3 retries") as error:
        send_chunk(never, ["x"], sleep=waits.append)
    assert len(calls) == 4 and waits == [1, 2, 4] and isinstance(error.value.__cause__, OSError)


def records(spark, n, partitions=3):
    return spark.createDataFrame([(json.dumps({"id": i}),) for i in range(n)], "record string").repartition(partitions)


def folder_sender(folder, fail_first=False):
    """Each chunk becomes one file; optionally every chunk is refused once."""

    def open_store():
        import hashlib

        def send(chunk):
            name = hashlib.md5("".join(chunk).encode()).hexdigest()
            if fail_first and not os.path.exists(f"{folder}/{name}.seen"):
                open(f"{folder}/{name}.seen", "w").close()
                return False
            with open(f"{folder}/{name}.json", "w") as file:
                json.dump(chunk, file)
            return True

        return send

    return open_store


def stored(folder):
    chunks = [json.load(open(os.path.join(folder, n))) for n in os.listdir(folder) if n.endswith(".json")]
    return [len(c) for c in chunks], sorted(json.loads(r)["id"] for c in chunks for r in c)


@pytest.mark.parametrize("flaky", [False, True])
def test_every_record_arrives_in_chunks(spark, tmp_path, flaky):
    sent = send_records(
        records(spark, 1050, 3), folder_sender(str(tmp_path), flaky), chunk_size=100, sleep=lambda s: None
    ).first()
    sizes, ids = stored(tmp_path)
    assert ids == list(range(1050)) and max(sizes) == 100
    assert (sent["rows"], sent["chunks"], sent["retries"]) == (1050, len(sizes), len(sizes) if flaky else 0)


def test_a_refused_chunk_fails_the_job(spark, tmp_path):
    def open_store():
        return lambda chunk: False

    with pytest.raises(Exception, match="failed after 3 retries"):
        send_records(records(spark, 5, 1), open_store, sleep=lambda s: None).collect()


def test_nothing_to_send(spark, tmp_path):
    sent = send_records(records(spark, 5).limit(0), folder_sender(str(tmp_path))).first()
    assert not sent["rows"]
