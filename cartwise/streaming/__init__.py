"""Structured Streaming: request-driven recommendations (stream-static join)."""

from .requests import REQUEST_SCHEMA, answer_requests, read_answers, run_request_stream, write_answer_tables

__all__ = ["REQUEST_SCHEMA", "answer_requests", "read_answers", "run_request_stream", "write_answer_tables"]
