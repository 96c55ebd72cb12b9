"""Errors, with the texts that job reports show.

Fixed values: these texts are part of the reports' format.
"""

from __future__ import annotations

import json


class MillraceError(Exception):
    """Base of all errors that a config or its data can cause."""


class ConfigParseError(MillraceError):
    """The config is not what the model takes."""


class EvalError(MillraceError):
    """An expression cannot be compiled for its input."""


class UnknownLookup(EvalError):
    def __init__(self, lookup: str) -> None:
        super().__init__(f"unknown lookup id: {lookup}")


class PipelineError(MillraceError):
    """A file, mapping or partition fails."""


class UnknownSourceContainer(PipelineError):
    def __init__(self, key: str) -> None:
        super().__init__(f"unknown source container for key `{key}`")


class NoMapping(PipelineError):
    def __init__(self, container: str) -> None:
        super().__init__(f"no mapping found for source container `{container}`")


class MissingColumns(PipelineError):
    def __init__(self, key: str, missing: list[str]) -> None:
        self.missing = missing
        super().__init__(f"CSV `{key}` missing required columns: {json.dumps(missing, ensure_ascii=False)}")


class FileFailed(PipelineError):
    def __init__(self, key: str, message: str) -> None:
        super().__init__(f"cannot read `{key}`: {message}")


class NoFilesSucceeded(PipelineError):
    def __init__(self) -> None:
        super().__init__("no files succeeded during ingestion")


class UnsupportedGranularity(PipelineError):
    def __init__(self, got: str) -> None:
        super().__init__(f'unsupported partition granularity: `{got}` (supported: "month")')


class PartitionUploadFailed(PipelineError):
    def __init__(self, key: str, message: str) -> None:
        super().__init__(f"partition upload failed for key `{key}`: {message}")
