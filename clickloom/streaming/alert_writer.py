"""Row writers of the alert sink; they run in the Python workers."""

from __future__ import annotations

import json
import logging
import uuid

logger = logging.getLogger("clickloom.alerts")


class AlertLogWriter:
    """Logs one line per alert. Delivery is at least once: a retry logs again."""

    def open(self, partition_id: int, epoch_id: int) -> bool:
        return True

    def process(self, row) -> None:
        logger.warning(row.alert_text)

    def close(self, error: Exception | None) -> None:
        if error is not None:
            logger.error("alert writer failed: %s", error)


class AlertFileWriter:
    """One JSON-lines file per partition and micro-batch with alerts, below a shared folder.

    A file shows under its name only when it is complete, and a partition that runs
    again replaces its own file, so a lost executor leaves no half and no doubled
    file. The folder must be one that ``pyarrow.fs`` reaches on the executors.
    """

    def __init__(self, folder: str) -> None:
        self.folder = folder
        self.out = None

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.name = f"{epoch_id:012d}-{partition_id:06d}.json"
        self.out = None
        return True

    def process(self, row) -> None:
        if self.out is None:
            self.files, self.path = shared_files(self.folder)
            self.files.create_dir(self.path, recursive=True)
            self.hidden = f"{self.path}/.{uuid.uuid4().hex}"
            self.out = self.files.open_output_stream(self.hidden)
        line = json.dumps({"event_id": row.event_id, "alert_text": row.alert_text})
        self.out.write(f"{line}\n".encode())

    def close(self, error: Exception | None) -> None:
        if self.out is None:
            return
        self.out.close()
        if error is not None:
            self.files.delete_file(self.hidden)
            return
        self.files.move(self.hidden, f"{self.path}/{self.name}")


def shared_files(uri: str) -> tuple:
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)
