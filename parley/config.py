"""Parameters of the pipeline.

Fixed values that must equal the reference's behaviour are kept together
here, in plain form.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values (reference behaviour) ---------------------------------
# Audio chunking: 5 minute chunks with 1.5 s overlap, in milliseconds.
MAX_CHUNK_MS = 300_000
CHUNK_OVERLAP_MS = 1_500
# Endpoint payload limit and the pre-encoding file limit derived from it.
MAX_PAYLOAD_BYTES = 16 * 1024 * 1024
BASE64_GROWTH = 1.34
# JSON envelope around the base64 audio: {"dataframe_records": [{"audio_base64": "..."}]}
PAYLOAD_ENVELOPE_BYTES = 45
# Message cuts.
PREPROCESS_ERROR_CHARS = 500
ENDPOINT_MESSAGE_CHARS = 100
ENDPOINT_BODY_CHARS = 200
FILE_ERROR_CHARS = 1000
PREVIEW_CHARS = 100
# Reassembly separators.
TEXT_SEPARATOR = " "
ERROR_SEPARATOR = "; "
CHUNK_PATH_SEPARATOR = "|"
# Preprocessing target format.
TARGET_SAMPLE_RATE = 16_000
TARGET_CHANNELS = 1
# Error taxonomy, first match wins, in this order; anything else is OTHER.
ERROR_CATEGORIES = ("CHUNK_TOO_LARGE", "PAYLOAD_TOO_LARGE", "MAX_REQUEST_SIZE_EXCEEDED")
# Default speaker labels when no name is known.
DEFAULT_SPEAKERS = ("Speaker 1", "Speaker 2")
# Rate limit of the serving endpoint, calls per minute.
RATE_LIMIT_CALLS_PER_MINUTE = 1000
# Audio file extensions picked up by discovery (case-sensitive).
AUDIO_GLOB = "*.{mp3,wav}"
# Message formats.
CHUNK_TOO_LARGE_FORMAT = "CHUNK_TOO_LARGE: Chunk %d/%d is %s MB"
PAYLOAD_TOO_LARGE_FORMAT = "PAYLOAD_TOO_LARGE: %s MB"
ENDPOINT_ERROR_PREFIX = "ENDPOINT_ERROR: "
ENDPOINT_ERROR_SEPARATOR = " - "
HTTP_CODE_PREFIX = "HTTP_"
UNKNOWN_ERROR_CODE = "UNKNOWN"
EXCEPTION_PREFIX = "EXCEPTION: "
# Request and response envelopes of the speech endpoint.
REQUEST_ENVELOPE = "dataframe_records"
AUDIO_FIELD = "audio_base64"
RESPONSE_ENVELOPES = ("predictions", "dataframe_records")
TRANSCRIPTION_FIELD = "transcription"
ERROR_CODE_FIELD = "error_code"
MESSAGE_FIELD = "message"
# File names.
RECORDING_NAME_FORMAT = "conversation_%03d.wav"
CHUNK_FILE_FORMAT = "%s_chunk%d.wav"
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class SizeLimits:
    """Request size guard.  ``max_file_bytes`` defaults to payload/1.34."""

    max_payload_bytes: int = MAX_PAYLOAD_BYTES
    max_file_bytes: int | None = None
    envelope_bytes: int = PAYLOAD_ENVELOPE_BYTES

    @property
    def file_limit(self) -> int:
        if self.max_file_bytes is not None:
            return self.max_file_bytes
        return int(self.max_payload_bytes / BASE64_GROWTH)


@dataclass(frozen=True)
class ChunkSpec:
    """Overlapping chunk plan over a length axis (ms of audio or characters)."""

    max_len: int = MAX_CHUNK_MS
    overlap: int = CHUNK_OVERLAP_MS
    drop_empty: bool = False

    @property
    def step(self) -> int:
        return self.max_len - self.overlap
