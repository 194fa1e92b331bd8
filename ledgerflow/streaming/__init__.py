"""Streaming chains: stateless transforms over a message stream."""
