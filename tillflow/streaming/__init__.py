"""Structured Streaming: message envelopes, landing with dead letters, POS intake, live views."""
