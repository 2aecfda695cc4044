"""Scalar column functions (FN1-21): hashing, encryption, text, time."""
