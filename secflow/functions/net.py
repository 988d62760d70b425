"""IP addresses as whole numbers that sort like the addresses, and networks as ranges of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from secflow.functions.text import let

IPV4 = r"^(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)$"
IPV4_TAIL = IPV4.strip("^$")
# A literal is plausible when it has only groups and one optional gap; the group count is checked below.
IPV6_SHAPE = (
    r"^(?=.*:)(?!.*::.*::)(?!.*:::)(?!:[^:])(?!.*[^:]:$)"
    r"[0-9A-Fa-f:]*(?:(?<=:)" + IPV4_TAIL + r")?$"
)
IPV6_GROUP = r"^[0-9A-Fa-f]{1,4}$"
LABEL = r"[\p{L}\p{N}](?:[\p{L}\p{N}_-]{0,61}[\p{L}\p{N}])?"
HOSTNAME = r"^(?=.{1,253}\.?$)" + LABEL + r"(?:[.]" + LABEL + r")*\.?$"
NUMERIC_LAST_LABEL = r"(^|[.])\d[^.]*\.?$"

# Networks that count as local.
PRIVATE_V4 = ["10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.1/32"]
PRIVATE_V6 = ["fd00::/8", "::1/128"]


def _v4_number(ip: Column) -> Column:
    parts = F.split(ip, r"\.")
    number = F.lit(0).cast("bigint")
    for i in range(4):
        number = number * 256 + F.get(parts, F.lit(i)).try_cast("bigint")
    return number


def _dotted_tail_as_groups(ip: Column) -> Column:
    """Rewrite ``…:a.b.c.d`` so that only hexadecimal groups remain."""
    number = _v4_number(F.regexp_extract(ip, "(" + IPV4_TAIL + ")$", 1))
    return F.when(
        F.instr(ip, ".") > 0,
        let(number, lambda n: F.concat(
            F.regexp_replace(ip, "[^:]*$", ""),
            F.hex(F.floor(n / 65536)), F.lit(":"), F.hex(n % 65536),
        )),
    ).otherwise(ip)


def _v6_hex(ip: Column) -> Column:
    """32 hex digits of an IPv6 literal, or NULL when it is not one."""
    none = F.array().cast("array<string>")

    def groups(part: Column) -> Column:
        return F.when(F.length(part) == 0, none).otherwise(F.split(part, ":"))

    def fill(sides: Column) -> Column:
        head, rest, gap = sides["head"], sides["rest"], sides["gap"]
        missing = F.lit(8) - F.size(head) - F.size(rest)
        zeros = F.when(missing > 0, F.array_repeat(F.lit("0"), missing)).otherwise(none)
        return F.when(F.when(gap, missing >= 1).otherwise(missing == 0), F.concat(head, zeros, rest))

    def digits(whole: Column) -> Column:
        return F.when(
            F.forall(whole, lambda g: g.rlike(IPV6_GROUP)),
            F.lower(F.array_join(F.transform(whole, lambda g: F.lpad(g, 4, "0")), "")),
        )

    def sides(text: Column) -> Column:
        gap = F.instr(text, "::") > 0
        left = F.substring_index(text, "::", 1)
        right = F.when(gap, F.substring_index(text, "::", -1)).otherwise(F.lit(""))
        return F.struct(groups(left).alias("head"), groups(right).alias("rest"), gap.alias("gap"))

    return let(let(let(_dotted_tail_as_groups(ip), sides), fill), digits)


def _word(hexed: Column, start: int) -> Column:
    """Eight hex digits as a number."""
    return F.conv(F.substring(hexed, start, 8), 16, 10).cast("bigint")


def _number(family: int, high: Column, low: Column) -> Column:
    return F.struct(F.lit(family).alias("family"), high.cast("bigint").alias("high"), low.cast("bigint").alias("low"))


def ip_number(ip: Column) -> Column:
    """(family, high, low) of an address; NULL for anything that is not an IP literal.

    An IPv4 address is ``low``.  An IPv6 address is both, each 64 bits less 2**63, so that signed
    numbers sort like addresses.  IPv4-mapped IPv6 addresses become plain IPv4 ones.
    """
    def parts(hexed: Column) -> Column:
        mapped = F.startswith(hexed, F.lit("0" * 20 + "ffff"))

        def half(start: int) -> Column:
            return F.shiftleft(_word(hexed, start) - (1 << 31), 32) + _word(hexed, start + 8)

        return F.when(mapped, _number(4, F.lit(0), _word(hexed, 25))).when(
            hexed.isNotNull(), _number(6, half(1), half(17)))

    return F.when(ip.rlike(IPV4), _number(4, F.lit(0), _v4_number(ip))).when(
        ip.rlike(IPV6_SHAPE), let(_v6_hex(ip), parts))


def is_ip(ip: Column) -> Column:
    v6 = F.when(ip.rlike(IPV6_SHAPE), _v6_hex(ip).isNotNull()).otherwise(False)
    return F.coalesce(ip.rlike(IPV4) | v6, F.lit(False))


def is_hostname(name: Column) -> Column:
    """Domain-name syntax: labels of 1..63 characters whose last one does not start with a digit."""
    ok = name.rlike(HOSTNAME) & ~name.rlike(NUMERIC_LAST_LABEL)
    return F.coalesce(ok, F.lit(False))


def network_range(address: Column, length: Column) -> Column:
    """First and last number of the network that an address (as a number) lies in, and its length.

    A length beyond that of the address is the address alone; NULL lengths give NULL.
    """
    v4 = address["family"] == 4
    size = F.greatest(F.lit(0), F.least(length, F.when(v4, 32).otherwise(128)))
    ones, sign = F.lit(-1).cast("bigint"), F.lit(-(1 << 63)).cast("bigint")

    def free(bits: Column, width: int) -> Column:
        """The lowest ``bits`` of ``width`` bits set; shifts by all 64 bits would shift by none."""
        whole = F.lit(-1 if width == 64 else (1 << width) - 1).cast("bigint")
        return F.when(bits >= width, whole).otherwise(
            F.call_function("shiftleft", ones, bits).bitwiseXOR(ones))

    def edges(value: Column, host: Column, last: bool) -> Column:
        return value.bitwiseOR(host) if last else value.bitwiseAND(host.bitwiseXOR(ones))

    high_free = free(F.greatest(F.lit(0), 64 - size), 64)
    low_free = free(F.least(F.lit(64), 128 - size), 64)
    columns = []
    for name, last in (("", False), ("last_", True)):
        high = edges(address["high"].bitwiseXOR(sign), high_free, last).bitwiseXOR(sign)
        low = edges(address["low"].bitwiseXOR(sign), low_free, last).bitwiseXOR(sign)
        low4 = edges(address["low"], free(32 - size, 32), last)
        columns += [F.when(v4, address["high"]).otherwise(high).alias(f"{name}high"),
                    F.when(v4, low4).otherwise(low).alias(f"{name}low")]
    return F.when(address.isNotNull() & length.isNotNull(), F.struct(
        address["family"].alias("family"), *columns, size.alias("length")))


def is_private_number(address: Column) -> Column:
    """Whether an address (as a number) lies in a local network; NULL when there is no address."""
    import ipaddress

    local = F.lit(False)
    for cidr in PRIVATE_V4:
        net = ipaddress.ip_network(cidr)
        first, last = int(net.network_address), int(net.broadcast_address)
        local = local | ((address["family"] == 4) & address["low"].between(first, last))
    for cidr in PRIVATE_V6:
        net = ipaddress.ip_network(cidr)
        (first, first_low), (last, last_low) = (
            (int(x) // 2**64 - 2**63, int(x) % 2**64 - 2**63) for x in (net.network_address, net.broadcast_address))
        inside = address["high"].between(first, last)
        if first == last:  # a network longer than 64 bits
            inside = inside & address["low"].between(first_low, last_low)
        local = local | ((address["family"] == 6) & inside)
    return F.when(address.isNotNull(), local)


def is_private_ip(ip: Column) -> Column:
    return let(ip_number(ip), is_private_number)
