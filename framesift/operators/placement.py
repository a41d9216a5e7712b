"""Which executors a stage may run on."""

from __future__ import annotations

import math

from framesift.config import RunConfig


def resource_profile(resource: str | None, per_task: float = 1.0):
    """Profile of a stage whose tasks each reserve some of an executor resource, or None
    when there is nothing to reserve.

    Needs a cluster manager with stage-level scheduling; a local session refuses it.
    """
    if not resource or per_task <= 0:
        return None
    from pyspark.resource import ExecutorResourceRequests, ResourceProfileBuilder
    from pyspark.resource import TaskResourceRequests

    executor = ExecutorResourceRequests().resource(resource, max(1, math.ceil(per_task)))
    task = TaskResourceRequests().cpus(1).resource(resource, per_task)
    return ResourceProfileBuilder().require(executor).require(task).build


def caption_profile(config: RunConfig):
    return resource_profile(config.resource, config.gpus_per_task)


def decode_profile(config: RunConfig):
    """Decoding has a stage of its own only where samples are staged."""
    return resource_profile(config.decode_resource) if config.placement == "staged" else None
