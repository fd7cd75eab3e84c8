"""Writers.  All of them let failures raise."""
