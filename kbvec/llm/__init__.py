"""Operators for preparing training corpora: copies, leaks, quality, secrets, tokens, chats, shards, neighbours."""
