"""Settings of a captioning run."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values the results depend on.
NUM_UNITS = 16
FRAME_SIZE = 384
PROMPT = "Describe what is happening in this video in one sentence."
MAX_NEW_TOKENS = 64
PREVIEW_ROWS = 100


@dataclass(frozen=True)
class RunConfig:
    backend: str = "batch"
    """Name of a registered backend, see ``operators.caption``."""

    reader: object = "text"
    """An asset reader or the name of a registered one, see ``operators.readers``."""

    model: object = "first-last"
    """A ``Model`` or the name of a registered one, see ``operators.models``."""

    num_units: int = NUM_UNITS
    batch_size: int = 2
    """Rows the model sees per call. The last call of a partition may be smaller."""

    gpu_concurrency: int = 2
    """Model replicas the cluster is meant to hold. Recorded with the run; what runs
    at once follows from the executors and ``gpus_per_task``."""

    gpus_per_task: float = 0.0
    """Share of ``resource`` one captioning task reserves; 0 asks for no resource
    profile."""

    resource: str = "gpu"
    """Executor resource the captioning stage needs: GPUs, or a label the cluster
    gives the machines it should be pinned to."""

    decode_resource: str | None = None
    """Executor resource, one per task, that pins decoding where samples are staged."""

    placement: str = "fused"
    """``fused``: one stage fetches, decodes and captions, so units never leave their
    task. ``staged``: samples are written first and captioned by a job of their own,
    which keeps decoding off the GPU machines and lets captioning start over without
    decoding again."""

    decode_threads: int = 2
    """Threads that read assets ahead of the model inside one task; 0 reads in line."""

    partitions: int | None = None
    """Tasks of the fetch, decode and caption stage; None fits them to the manifest."""

    on_error: str = "drop"
    """``drop`` keeps unreadable assets out of the result and lists them in the
    rejected table; ``fail`` stops the job at the first one."""

    on_fetch_error: str = "fail"
    """``fail``: an asset that cannot be fetched stops the job.
    ``quarantine``: it goes to the rejected table."""

    min_variety: float = 0.0
    """Least share of distinct captions among a run's captions. A run below it is held
    back: nothing is published and ``HeldBack`` says why. 0 lets every run pass."""

    write_mode: str = "errorifexists"
    output_subdir: str = "captions"

    def output_path(self, base: str) -> str:
        return "{}/{}-{}".format(base.rstrip("/"), self.output_subdir, self.backend)
