"""Part of saltmesh."""
