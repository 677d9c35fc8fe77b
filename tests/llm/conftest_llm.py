"""Small helpers of the tests."""

import hashlib


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
