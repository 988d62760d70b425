"""Device words mapped to canonical names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_ACTION = "UnknownInteractionCategory"
UNKNOWN_STATUS = "UnknownInteractionStatus"
UNKNOWN_IMPORTANCE = "UnknownImportanceLevel"
UNKNOWN_COUNTERPART = "UnknownCounterpart"

# Device words and the canonical action each one stands for.
ACTION_WORDS = {
    "access": "access",
    "alert": "alert",
    "allow": "allow",
    "apply": "apply",
    "backup": "backup",
    "bind": "bind",
    "call": "call",
    "check": "check",
    "clean": "clean",
    "close": "close",
    "configure": "configure",
    "connect": "connect",
    "copy": "copy",
    "create": "create",
    "decrypt": "decrypt",
    "deliver": "deliver",
    "deny": "deny",
    "detect": "detect",
    "disable": "disable",
    "disconnect": "disconnect",
    "down": "down",
    "download": "download",
    "enable": "enable",
    "encrypt": "encrypt",
    "exclude": "exclude",
    "execute": "execute",
    "extract": "extract",
    "grant": "grant",
    "info": "info",
    "initiate": "initiate",
    "install": "install",
    "leak": "leak",
    "lock": "lock",
    "login": "login",
    "logout": "logout",
    "modify": "modify",
    "move": "move",
    "open": "open",
    "print": "print",
    "protect": "protect",
    "quarantine": "quarantine",
    "receive": "receive",
    "reject": "reject",
    "remove": "remove",
    "restart": "restart",
    "revoke": "revoke",
    "rollback": "rollback",
    "scan": "scan",
    "search": "search",
    "send": "send",
    "start": "start",
    "stop": "stop",
    "sync": "sync",
    "terminate": "terminate",
    "unbind": "unbind",
    "uninstall": "uninstall",
    "unlock": "unlock",
    "up": "up",
    "update": "update",
    "upgrade": "upgrade",
    "upload": "upload",
    "view": "view",
    "unknown": UNKNOWN_ACTION,
    "accept": "connect",
    "detected": "detect",
    "negotiate": "initiate",
    "install_sa": "install",
    "auth-logon": "login",
    "fsso-logon": "login",
    "auth-logout": "logout",
    "fsso-logoff": "logout",
    "roll-log": "modify",
    "block": "reject",
    "delete_ipsec_sa": "remove",
    "server-rst": "reset",
    "client-rst": "reset",
    "rstore": "restore",
    "dns": "search",
    "timeout": "terminate",
    "tunnel-up": "up",
    "unban": "allow",
    "ban": "deny",
}

# Actions of the single-line audit record types.
AUDIT_TYPE_ACTIONS = {
    "ADD_GROUP": "create",
    "ADD_USER": "create",
    "DEL_GROUP": "remove",
    "DEL_USER": "remove",
    "EXECVE": "execute",
    "AVC": "check",
    "SERVICE_START": "start",
    "SERVICE_STOP": "stop",
    "USER_AUTH": "login",
    "USER_CHAUTHTOK": "modify",
    "USER_CMD": "execute",
    "USER_END": "logout",
    "USER_LOGIN": "login",
}

# Statuses.
STATUS_WORDS = {
    "unknown": UNKNOWN_STATUS,
    "failure": "failure",
    "denied": "failure",
    "failed": "failure",
    "no": "failure",
    "success": "success",
    "granted": "success",
    "yes": "success",
    "succeeded": "success",
    "ongoing": "ongoing",
    "logon": "ongoing",
}

# Importance levels.
IMPORTANCE_WORDS = {
    "unknown": UNKNOWN_IMPORTANCE,
    "information": "INFO",
    "notice": "INFO",
    "inform": "INFO",
    "debug": "INFO",
    "1": "INFO",
    "info": "INFO",
    "warning": "LOW",
    "medium": "LOW",
    "moderate": "LOW",
    "2": "LOW",
    "error": "MEDIUM",
    "high": "MEDIUM",
    "3": "MEDIUM",
    "critical": "HIGH",
    "alert": "HIGH",
    "emergency": "HIGH",
    "emerge": "HIGH",
    "severe": "HIGH",
    "критический": "HIGH",
    "4": "HIGH",
}

# Importance of the network vendor's numeric severities.
CISCO_IMPORTANCE = {
    "1": "INFO",
    "2": "HIGH",
    "3": "LOW",
    "4": "MEDIUM",
    "5": "INFO",
    "6": "INFO",
    "7": "INFO",
}

# Object categories.
COUNTERPART_WORDS = {
    "unknown": UNKNOWN_COUNTERPART,
    "account": "account",
    "application": "application",
    "host": "host",
    "process": "process",
    "rule": "rule",
    "system": "system",
    "file": "file",
    "url": "url",
    "malwareobject": "malwareObject",
    "mailattachment": "mailAttachment",
}

# Object categories of the single-line audit record types.
AUDIT_TYPE_COUNTERPARTS = {
    "SERVICE_START": "process",
    "SERVICE_STOP": "process",
    "USER_AUTH": "system",
    "USER_END": "system",
    "USER_LOGIN": "system",
    "ADD_USER": "account",
    "DEL_USER": "account",
    "USER_CHAUTHTOK": "account",
    "ADD_GROUP": "userGroup",
    "DEL_GROUP": "userGroup",
    "EXECVE": "command",
    "USER_CMD": "command",
}

# IP protocol numbers and names (IANA assignment).
PROTOCOLS = {
    0: "HOPOPT", 1: "ICMP", 2: "IGMP", 3: "GGP", 4: "IPv4", 5: "ST", 6: "TCP", 7: "CBT", 8: "EGP", 9: "IGP",
    10: "BBN-RCC-MON", 11: "NVP-II", 12: "PUP", 13: "ARGUS", 14: "EMCON", 15: "XNET", 16: "CHAOS", 17: "UDP",
    18: "MUX", 19: "DCN-MEAS", 20: "HMP", 21: "PRM", 22: "XNS-IDP", 23: "TRUNK-1", 24: "TRUNK-2", 25: "LEAF-1",
    26: "LEAF-2", 27: "RDP", 28: "IRTP", 29: "ISO-TP4", 30: "NETBLT", 31: "MFE-NSP", 32: "MERIT-INP",
    33: "DCCP", 34: "3PC", 35: "IDPR", 36: "XTP", 37: "DDP", 38: "IDPR-CMTP", 39: "TP++", 40: "IL", 41: "IPv6",
    42: "SDRP", 43: "IPv6-Route", 44: "IPv6-Frag", 45: "IDRP", 46: "RSVP", 47: "GRE", 48: "DSR", 49: "BNA",
    50: "ESP", 51: "AH", 52: "I-NLSP", 53: "SWIPE", 54: "NARP", 55: "MOBILE", 56: "TLSP", 57: "SKIP",
    58: "IPv6-ICMP", 59: "IPv6-NoNxt", 60: "IPv6-Opts", 62: "CFTP", 64: "SAT-EXPAK", 65: "KRYPTOLAN", 66: "RVD",
    67: "IPPC", 69: "SAT-MON", 70: "VISA", 71: "IPCV", 72: "CPNX", 73: "CPHB", 74: "WSN", 75: "PVP",
    76: "BR-SAT-MON", 77: "SUN-ND", 78: "WB-MON", 79: "WB-EXPAK", 80: "ISO-IP", 81: "VMTP", 82: "SECURE-VMTP",
    83: "VINES", 84: "TTP/IPTM", 85: "NSFNET-IGP", 86: "DGP", 87: "TCF", 88: "EIGRP", 89: "OSPFIGP",
    90: "Sprite-RPC", 91: "LARP", 92: "MTP", 93: "AX.25", 94: "IPIP", 95: "MICP", 96: "SCC-SP", 97: "ETHERIP",
    98: "ENCAP", 100: "GMTP", 101: "IFMP", 102: "PNNI", 103: "PIM", 104: "ARIS", 105: "SCPS", 106: "QNX",
    107: "A/N", 108: "IPComp", 109: "SNP", 110: "Compaq-Peer", 111: "IPX-in-IP", 112: "VRRP", 113: "PGM",
    115: "L2TP", 116: "DDX", 117: "IATP", 118: "STP", 119: "SRP", 120: "UTI", 121: "SMP", 122: "SM", 123: "PTP",
    124: "ISIS", 125: "FIRE", 126: "CRTP", 127: "CRUDP", 128: "SSCOPMCE", 129: "IPLT", 130: "SPS", 131: "PIPE",
    132: "SCTP", 133: "FC", 134: "RSVP-E2E-IGNORE", 136: "UDPLite", 137: "MPLS-in-IP", 138: "manet", 139: "HIP",
    140: "Shim6", 141: "WESP", 142: "ROHC", 143: "Ethernet",
}
# Two names that share a number, under which either is known.
PROTOCOL_ALIASES = {"ttp": "TTP/IPTM", "iptm": "TTP/IPTM"}


def merge_words(*tables: dict[str, str]) -> dict[str, str]:
    """Join word tables under lower-cased words; one word with two meanings is an error."""
    merged: dict[str, str] = {}
    for table in tables:
        for word, name in table.items():
            if merged.setdefault(word.lower(), name) != name:
                raise ValueError(f"{word!r} means both {merged[word.lower()]!r} and {name!r}")
    return merged


def protocol_words() -> dict[str, str]:
    numbers = {str(number): name for number, name in PROTOCOLS.items()}
    return {**numbers, **{name.lower(): name for name in PROTOCOLS.values() if "TTP" not in name}, **PROTOCOL_ALIASES}


def _literal_map(words: dict[str, str]) -> Column:
    """The table as one constant; no word contains a tab or a line end."""
    text = "\n".join(f"{word}\t{name}" for word, name in words.items())
    return F.str_to_map(F.lit(text), F.lit("\n"), F.lit("\t"))


def lookup(value: Column, words: dict[str, str], unknown: str | None) -> Column:
    found = F.try_element_at(_literal_map(words), F.lower(value))
    return found if unknown is None else F.coalesce(found, F.lit(unknown))


ACTIONS = merge_words(ACTION_WORDS, AUDIT_TYPE_ACTIONS)
COUNTERPARTS = merge_words(COUNTERPART_WORDS, AUDIT_TYPE_COUNTERPARTS)


def to_action(value: Column, extra: dict[str, str] | None = None) -> Column:
    return lookup(value, merge_words(ACTIONS, extra or {}), UNKNOWN_ACTION)


def to_status(value: Column) -> Column:
    return lookup(value, STATUS_WORDS, UNKNOWN_STATUS)


def to_importance(value: Column) -> Column:
    return lookup(value, IMPORTANCE_WORDS, UNKNOWN_IMPORTANCE)


def to_counterpart(value: Column, extra: dict[str, str] | None = None) -> Column:
    return lookup(value, merge_words(COUNTERPARTS, extra or {}), UNKNOWN_COUNTERPART)


def cisco_importance(value: Column) -> Column:
    return lookup(value, CISCO_IMPORTANCE, None)


def protocol_name(value: Column) -> Column:
    return F.coalesce(lookup(value, protocol_words(), None), value)


# Windows access-mask bits and the action each one means, most telling bit first.
ACCESS_MASK_ACTIONS = [
    (0x10000, "remove"),     # DELETE
    (0x40, "remove"),        # DELETE_DIR
    (0x2, "modify"),         # WRITE
    (0x100, "modify"),       # WRITE_ATTR
    (0x10, "modify"),        # WRITE_EXT_ATTR
    (0x1000000, "modify"),   # WRITE_SACL
    (0x4, "modify"),         # APPEND
    (0x1, "access"),         # READ
    (0x80, "access"),        # READ_ATTR
    (0x8, "access"),         # READ_EXT_ATTR
    (0x20000, "access"),     # READ_SACL
    (0x20, "execute"),       # EXECUTE
    (0x40000, "grant"),      # CHMOD
    (0x80000, "grant"),      # CHOWN
    (0x100000, "sync"),      # SYNC
]


def access_mask_action(mask: Column) -> Column:
    bits = F.conv(F.regexp_replace(mask, "^0[xX]", ""), 16, 10).try_cast("bigint")
    action = F.lit(UNKNOWN_ACTION)
    for bit, name in reversed(ACCESS_MASK_ACTIONS):
        action = F.when(bits.bitwiseAND(F.lit(bit).cast("bigint")) != 0, name).otherwise(action)
    return action
