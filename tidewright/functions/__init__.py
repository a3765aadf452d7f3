"""Column functions: exact quantization, timecode, text and levels."""
