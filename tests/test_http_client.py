import base64
import io
import json
import urllib.error
import urllib.request

from parley.operators.inference import HttpEndpointClient


class _Resp(io.BytesIO):
    def __init__(self, body: bytes, status: int = 200):
        super().__init__(body)
        self.status = status

    def __enter__(self):
        return self

    def __exit__(self, *a):
        return False


def test_request_shape_and_success(monkeypatch):
    seen = {}

    def fake_urlopen(req, timeout):
        seen["url"], seen["timeout"] = req.full_url, timeout
        seen["headers"] = {k.lower(): v for k, v in req.header_items()}
        seen["body"] = json.loads(req.data)
        return _Resp(b'{"predictions": [{"transcription": "hello"}]}')

    monkeypatch.setattr(urllib.request, "urlopen", fake_urlopen)
    c = HttpEndpointClient("https://host/invocations", token="t0k", timeout=12.0)
    status, body = c(b"RIFF....")
    assert status == 200 and json.loads(body)["predictions"][0]["transcription"] == "hello"
    assert seen["timeout"] == 12.0 and seen["headers"]["authorization"] == "Bearer t0k"
    rec = seen["body"]["dataframe_records"][0]
    assert base64.b64decode(rec["audio_base64"]) == b"RIFF...."
    # the wire size matches the size guard's arithmetic: base64 + 45 bytes
    assert len(json.dumps(seen["body"]).encode()) == 4 * ((8 + 2) // 3) + 45


def test_http_error_returns_status_and_body(monkeypatch):
    def fake_urlopen(req, timeout):
        raise urllib.error.HTTPError(req.full_url, 429, "Too Many", {},
                                     io.BytesIO(b'{"error_code": "REQUEST_LIMIT_EXCEEDED", "message": "slow down"}'))

    monkeypatch.setattr(urllib.request, "urlopen", fake_urlopen)
    status, body = HttpEndpointClient("https://host/x")(b"x")
    assert status == 429 and "REQUEST_LIMIT_EXCEEDED" in body
