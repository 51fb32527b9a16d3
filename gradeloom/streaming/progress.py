"""Counts of what became of the rows of a stream, batch by batch, from its progress reports."""

from pyspark.sql.streaming import StreamingQueryListener


class BatchCounts(StreamingQueryListener):
    """Keeps the observed metrics of the queries of a session: `batches[run][batch]` is a dict of counts.

    Metrics come from `DataFrame.observe` on the stream, as `stream_score` sets them. Register it with
    `spark.streams.addListener`; reports come shortly after the batch. The last `keep` batches of a run stay.
    """

    def __init__(self, keep: int = 10_000):
        super().__init__()
        self.keep = keep
        self.batches: dict[str, dict[int, dict[str, int]]] = {}

    def onQueryStarted(self, event) -> None:
        self.batches.setdefault(str(event.runId), {})

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = {name: value for row in progress.observedMetrics.values() for name, value in row.asDict().items()}
        of_run = self.batches.setdefault(str(progress.runId), {})
        if found:
            of_run[progress.batchId] = found
            for old in sorted(of_run)[: -self.keep]:
                del of_run[old]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def total(self, run: str) -> dict[str, int]:
        out: dict[str, int] = {}
        for counts in self.batches.get(run, {}).values():
            for name, value in counts.items():
                out[name] = out.get(name, 0) + value
        return out
