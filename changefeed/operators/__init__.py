"""DataFrame operators; each works on a bounded table and, unless it says otherwise, on a stream."""
