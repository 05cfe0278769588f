"""Callbacks for the batch-capture test (importable by Python workers)."""


def fail_on_bad(piece):
    if (piece["value"] == "bad").any():
        raise ValueError("bad value in resource")
    return piece


def double_in_pieces(resource, pieces):
    """Yields per piece; fails in the middle of a resource that holds 'bad'."""
    seen = 0
    for piece in pieces:
        if (piece["value"] == "bad").any():
            raise ValueError(f"bad value in {resource}")
        assert piece["entry_number"].iloc[0] == seen + 1 and piece["entry_number"].is_monotonic_increasing
        seen = int(piece["entry_number"].iloc[-1])
        yield piece.assign(value=piece["value"] * 2)[["resource", "entry_number", "value"]]
