"""Fixtures: deterministic endpoints for the registered queries and tests.

They are not part of the pipeline; jobs inject a real client.
"""

from __future__ import annotations

import io
import json
import math
import wave

from parley import config


class EchoClient:
    """Deterministic stand-in for a speech endpoint.

    The payload already is the spoken text, so the "transcription" is the
    payload itself.  Requests larger than ``request_limit`` bytes (JSON size)
    are refused with a 400 ``MAX_REQUEST_SIZE_EXCEEDED`` envelope, the way a
    serving endpoint enforces its request cap.  ``refuse_every``: payloads
    whose length it divides are answered with 503 ``busy``.
    """

    def __init__(self, request_limit: int | None = None, envelope: int = config.PAYLOAD_ENVELOPE_BYTES,
                 key: str = "predictions", refuse_every: int | None = None):
        self.request_limit = request_limit
        self.envelope = envelope
        self.key = key
        self.refuse_every = refuse_every

    def request_bytes(self, payload: str) -> int:
        n = len(payload.encode("utf-8"))
        return 4 * math.ceil(n / 3) + self.envelope

    def __call__(self, payload: str) -> tuple[int, str]:
        size = self.request_bytes(payload)
        if self.request_limit is not None and size > self.request_limit:
            return 400, json.dumps({
                config.ERROR_CODE_FIELD: "MAX_REQUEST_SIZE_EXCEEDED",
                config.MESSAGE_FIELD: f"Request size {size} exceeds the limit of {self.request_limit} bytes"})
        if self.refuse_every and len(payload) % self.refuse_every == 0:
            return 503, "busy"
        return 200, json.dumps({self.key: [{config.TRANSCRIPTION_FIELD: payload, "error": None}]},
                               ensure_ascii=False)


class WavSumClient:
    """Stand-in for a speech endpoint on WAV payloads: the "transcription" of
    a chunk is ``frames <n> sum <sum of samples>``, so it depends on every
    sample.  Undecodable audio is answered with a 400 ``BAD_AUDIO`` envelope."""

    def __call__(self, payload) -> tuple[int, str]:
        import numpy as np
        try:
            with wave.open(io.BytesIO(bytes(payload)), "rb") as w:
                samples = np.frombuffer(w.readframes(w.getnframes()), "<i2")
        except Exception as e:  # noqa: BLE001 - any decode failure is a bad request
            return 400, json.dumps({config.ERROR_CODE_FIELD: "BAD_AUDIO", config.MESSAGE_FIELD: str(e)})
        text = f"frames {len(samples)} sum {int(samples.sum(dtype=np.int64))}"
        return 200, json.dumps({config.RESPONSE_ENVELOPES[0]: [{config.TRANSCRIPTION_FIELD: text}]})
