"""Writers with the supported save modes and layouts."""
